"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulbook.llm.common import batched, mixed, shingle_hashes, text_or_empty, word_codes, word_hashes

SHINGLE = 5
CONTAINED = 0.8
MISSED = 4e-6           # chance that a window holding a template meets it in no band
TEMPLATE_WORDS = 200_000   # bound on the words of all templates, which are broadcast

# Short notices of common licenses.
NOTICES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
           "is furnished to do so, subject to the following conditions:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met:",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                  "the License. You may obtain a copy of the License at",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
               "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
               "distributed with this file, You can obtain one at",
    "all-rights-reserved": "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without "
                           "the prior written permission of the publisher.",
}

#: ASCII marks become spaces; all other characters, digits and letters stay.
_plain = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def license_words(text: str) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.lower().encode().translate(_plain).split()


def _shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [license_words(t) for t in texts]
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    codes, kinds = word_codes([w for p in parts for w in p])
    return shingle_hashes(word_hashes(kinds)[codes], lengths, SHINGLE)


def window_plan(runs: int) -> tuple[int, int, int]:
    """Step in shingles, steps a window, and bands of one hash each, for templates of ``runs`` shingles.

    A match holds at least 0.8 of the template within a stretch of 1.25 times its length
    (its own length below five shingles, where all are needed). Every stretch lies whole
    in some window, so with that window J is at least ``agree``, and the bands make the
    chance that none of them meets less than ``MISSED``.
    """
    needed = math.ceil(CONTAINED * runs)
    stretch = runs if needed == runs else math.ceil(runs / CONTAINED)
    step = max(1, runs // 4)
    steps = math.ceil((stretch + step - 1) / step)
    agree = needed / (steps * step + runs - needed)
    return step, steps, 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log(1 - agree))


class Templates:
    """Templates by shingle count, with the bands that their windows are looked up by."""

    def __init__(self, names: list[str], texts: list[str]):
        hashes, owner = _shingles(texts)
        self.names, self.sets = names, [np.unique(hashes[owner == i]) for i in range(len(names))]
        self.by_size: dict[int, list[int]] = {}
        for i, s in enumerate(self.sets):
            if len(s):
                self.by_size.setdefault(len(s), []).append(i)
        self.bands = {size: [(np.array([mixed(self.sets[i], b).min() for i in own]), own) for b in range(window_plan(size)[2])]
                      for size, own in self.by_size.items()}

    def scan(self, hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first and last shingle, containment) of every window that holds a template."""
        found = []
        if not len(hashes):
            return found
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        counts = np.diff(np.append(starts, len(owner)))
        place = np.arange(len(owner)) - np.repeat(starts, counts)
        images = {}
        for size in self.by_size:
            step, per, _ = window_plan(size)
            # Blocks of ``step`` shingles from each text's start; a window is a run of blocks.
            heads = np.flatnonzero(place % step == 0)
            text, ends = owner[heads], np.repeat(starts + counts, counts)[heads]
            near = set()
            for b, (values, own) in enumerate(self.bands[size]):
                if b not in images:
                    images[b] = mixed(hashes, b)
                low = np.minimum.reduceat(images[b], heads)
                window = low.copy()
                for k in range(1, per):
                    same = text[:-k] == text[k:]
                    window[:-k] = np.where(same, np.minimum(window[:-k], low[k:]), window[:-k])
                for value, template in zip(values, own):
                    near.update((int(at), template) for at in np.flatnonzero(window == value))
            for at, template in near:
                first = heads[at]
                last = min(first + per * step, ends[at])
                inside = np.isin(hashes[first:last], self.sets[template])
                share = len(np.unique(hashes[first:last][inside])) / len(self.sets[template])
                if share >= CONTAINED:
                    hits = np.flatnonzero(inside) + place[first]
                    found.append((int(text[at]), template, int(hits[0]), int(hits[-1]), share))
        return found


def joined_spans(found: list[tuple[int, int, int, int, float]]) -> list[tuple[int, int, int, int, float]]:
    """Overlapping windows of one text and template as one span with the best containment."""
    out: list[list] = []
    for row in sorted(found):
        if out and out[-1][:2] == list(row[:2]) and row[2] <= out[-1][3]:
            out[-1][3], out[-1][4] = max(out[-1][3], row[3]), max(out[-1][4], row[4])
        else:
            out.append(list(row))
    return [tuple(r) for r in out]


def license_scan(docs: DataFrame, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per license found: id, ``license``, ``first_word`` and ``last_word`` of the span, ``containment``.

    A window of a text counts when it holds at least 0.8 of a template's distinct
    five-word shingles (words in lower case without ASCII punctuation; a shorter
    template is one shingle). Windows overlap, so no place is missed at their edges.
    Null and empty texts hold no license; an empty table or no notices give no rows. A
    license that occurs twice gives two spans, repeated rows repeat their spans. All of
    a text is read. Notices are broadcast and so must have at most 200,000 words.
    """
    if sum(len(license_words(t)) for t in notices.values()) > TEMPLATE_WORDS:
        raise ValueError("too many words in the notices to broadcast")
    names, texts = list(notices), list(notices.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates(names, texts)
        for part in batched(frames, "text", 4_000_000):
            hashes, owner = _shingles(part["text"].tolist())
            ids = part["_id"].tolist()
            rows = [(ids[t], names[k], a, b + SHINGLE - 1, share) for t, k, a, b, share in joined_spans(templates.scan(hashes, owner))]
            yield pd.DataFrame(rows, columns=["_id", "license", "first_word", "last_word", "containment"])

    source = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    return (source.mapInPandas(run, f"_id {kind}, license string, first_word long, last_word long, containment double")
            .withColumnRenamed("_id", id_col))
