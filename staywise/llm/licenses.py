"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Templates are classed by their number of word shingles, S = the next power of two. A document's shingles are cut into
steps of S / 2, and each three steps in a row are a window, so any S shingles in a row lie within one. A window and a
template that holds ``containment`` of its shingles there then have a Jaccard similarity of a known least value, and a
class takes as many one-row MinHash bands as make a collision at that value certain to ``certainty``. Windows and
templates that collide are compared by their shingles; matches of one template that overlap are one.

Every document is worked off in one pass over its whole text, without a shuffle; the templates are a fixed list.

Inputs without a result of their own: an empty table gives no rows; null and empty texts, and texts of fewer words than
a shingle, have no matches; repeated rows get a row each; other columns pass by unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from staywise.llm import words

# License notices as they stand in files and on pages.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Production parameters.
SHINGLE = 5
CONTAINMENT = 75
CERTAINTY = 0.9999


@dataclass
class TemplateClass:
    """Templates of one size: names, sorted shingle sets, and their MinHash values by band."""

    step: int
    names: list[str]
    sets: list[np.ndarray]
    least: np.ndarray  # band x template


def _multipliers(n: int) -> np.ndarray:
    """Odd numbers, one per hash function."""
    return words._mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def _hashed(shingles: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    return ((shingles * multiplier) >> np.uint64(32)).astype(np.uint32)


def bands_needed(size: int, window: int, containment: int, certainty: float) -> int:
    """One-row bands that make a window and a contained template of ``size`` shingles collide with that certainty."""
    held = -(-size * containment // 100)
    similarity = held / (window + size - held)
    return 1 if similarity >= 1 else math.ceil(math.log(1 - certainty) / math.log(1 - similarity))


def template_classes(
    templates: dict[str, str], shingle: int = SHINGLE, containment: int = CONTAINMENT, certainty: float = CERTAINTY
) -> list[TemplateClass]:
    names = sorted(templates)
    found = words.split_words(*words.utf8(pa.array([templates[n] for n in names], pa.string())), words.ALNUM)
    by_size: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, own in zip(names, words.shingle_sets(found, shingle), strict=True):
        if len(own):
            by_size.setdefault(1 << (len(own) - 1).bit_length(), []).append((name, own))
    classes = []
    for size, members in sorted(by_size.items()):
        window = 3 * max(1, size // 2) if size > 1 else 1
        bands = max(bands_needed(len(s), window, containment, certainty) for _, s in members)
        least = np.array([[_hashed(s, m).min() for _, s in members] for m in _multipliers(bands)])
        classes.append(TemplateClass(max(1, size // 2), [n for n, _ in members], [s for _, s in members], least))
    return classes


def _windows(first: np.ndarray, shingle: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first shingle of each step, its text, last shingle of the text + 1); texts without shingles have no step."""
    n = np.maximum(np.diff(first) - shingle + 1, 0)
    steps = -(-n // step)
    text = np.repeat(np.arange(len(n)), steps)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(steps) - steps, steps)
    return first[text] + nth * step, text, (first[:-1] + n)[text]


def candidates(shingles: np.ndarray, first: np.ndarray, shingle: int, group: TemplateClass) -> tuple[np.ndarray, ...]:
    """(text, first shingle, end, template) of the windows that collide with a template in some band."""
    begin, text, end = _windows(first, shingle, group.step)
    if not len(begin):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    width = 1 if group.step == 1 and group.least.shape[0] == 1 else 3
    hit = np.zeros((len(group.names), len(begin)), dtype=bool)
    inside = np.minimum(begin + group.step, end)
    # between a text's last shingle and the next text's first stand those that run over the border: a step ends before
    limits = np.column_stack([begin, inside]).ravel()
    last = limits[-1] == len(shingles)
    limits = limits[:-1] if last else limits
    for multiplier, least in zip(_multipliers(group.least.shape[0]), group.least, strict=True):
        smallest = np.minimum.reduceat(_hashed(shingles, multiplier), limits)[::2]
        window = smallest.copy()
        for k in range(1, width):
            same = text[k:] == text[:-k]
            window[:-k][same] = np.minimum(window[:-k][same], smallest[k:][same])
        for t, value in enumerate(least):
            hit[t] |= window == value
    template, at = np.nonzero(hit)
    return text[at], begin[at], np.minimum(begin[at] + width * group.step, end[at]), template


def scan(part: pa.RecordBatch, classes: list[TemplateClass], shingle: int = SHINGLE, containment: int = CONTAINMENT) -> list[list[dict]]:
    """Per text its matches: template, first and last word, containment."""
    found = words.split_words(*words.utf8(part.column("text")), words.ALNUM)
    shingles = words.shingle_hashes(found.hash, shingle)
    out: list[list[dict]] = [[] for _ in range(part.num_rows)]
    if not len(shingles):
        return out
    for group in classes:
        spans: dict[tuple[int, int], list[list[float]]] = {}
        for text, a, b, t in zip(*[x.tolist() for x in candidates(shingles, found.first, shingle, group)], strict=True):
            own = group.sets[t]
            place = np.flatnonzero(np.isin(shingles[a:b], own))
            held = len(np.unique(shingles[a:b][place]))
            if held * 100 < len(own) * containment:
                continue
            base = int(found.first[text])
            span = [a + int(place[0]) - base, a + int(place[-1]) + shingle - 1 - base, held / len(own)]
            known = spans.setdefault((text, t), [])
            if known and span[0] <= known[-1][1]:
                known[-1] = [min(known[-1][0], span[0]), max(known[-1][1], span[1]), max(known[-1][2], span[2])]
            else:
                known.append(span)
        for (text, t), each in spans.items():
            out[text] += [
                {"template": group.names[t], "first_word": int(a), "last_word": int(b), "containment": c} for a, b, c in each
            ]
    return [sorted(m, key=lambda x: (x["first_word"], x["template"])) for m in out]


MATCH = pa.struct(
    [("template", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())]
)


def _scan_rows(classes: list[TemplateClass], shingle: int, containment: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                matches = pa.array(scan(part, classes, shingle, containment), pa.list_(MATCH))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), matches], ["doc_id", "matches"])

    return rows


def license_matches(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    shingle: int = SHINGLE,
    containment: int = CONTAINMENT,
    certainty: float = CERTAINTY,
) -> DataFrame:
    """Per row: doc_id, matches (template, first_word, last_word, containment), in order of place."""
    classes = template_classes(templates, shingle, containment, certainty)
    schema = "doc_id long, matches array<struct<template: string, first_word: long, last_word: long, containment: double>>"
    return docs.select("doc_id", "text").transform(words.map_texts, _scan_rows(classes, shingle, containment), schema)
