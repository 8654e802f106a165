r"""License scans: MinHash bands over overlapping word windows retrieve templates, exact containment
verifies them.

Words ``[^\x20\x09-\x0D]+`` are lower-cased (A-Z); shingles are five words. A template of m shingle
positions belongs to the scale B, the power of two from m up. At each scale a text's shingle
positions are cut into blocks of B, and window k is blocks k and k+1: windows overlap by half, so
any m positions in a row lie within one window.

*Guarantee.* A window that contains a share c of the template's shingles has Jaccard similarity of
at least c*m / (2B + (1-c)*m) > c / (5-c) with it. Each of the ``bands`` bands is one MinHash coordinate, so a
match is missed with probability below (1 - c/(5-c))^bands: under 2e-9 for c = 0.8 and 96 bands. A
band can only agree if the window holds the template's least shingle, so windows that hold no
template shingle at all are passed over without a loss.

*Verification.* A retrieved (window, template) pair counts if the window holds at least ``percent`` of the
template's distinct shingles.

*Full texts.* ``scan`` with ``bare`` strips comment markers and other outer punctuation from the words
on both sides, so a text matches in ``#``, ``//`` and ``*`` comments, and words of punctuation alone go.
``full_templates`` has the published texts beside this module and more notices. Where two of a window's
matches share words (GPL notices of two versions), one counts only if the window also holds at least half of
the shingles that tell it from the other, unless it has none.

The templates travel in the task: a fixed list. Nothing is shuffled; a text never leaves its row.

Defined results: one row per (row, template) with a match; null, empty and short texts give none; rows
that repeat give their matches each; null ids stay; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.hashing import (hash_ranges, lower_ascii_bytes, mix, shingles, slices, text_buffer,
                                words)

SHINGLE = 5

# Notices by which public licenses are referred to or granted.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at"),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"),
    "CC BY 4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC BY-NC 4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


# Further notices, for scans with bare words.
NOTICES = {
    "AGPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0.",
    "CC BY-SA 4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "EPL-2.0 notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at"),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version."),
    "LGPL-2.1 notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0 notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
}


def full_templates() -> dict[str, str]:
    """All notices, and the published texts in ``licenses`` (short ones without their copyright lines)."""
    texts = {x.name.removesuffix(".txt") + " text": x.read_text(encoding="utf-8")
             for x in resources.files("quarry.llm").joinpath("licenses").iterdir()
             if x.name.endswith(".txt")}
    return TEMPLATES | NOTICES | dict(sorted(texts.items()))


INNER = np.zeros(256, dtype=bool)
INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def bare_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words without outer punctuation (ASCII, Latin-1 signs, dashes and quotes); the others of
    their row move up where nothing is left."""
    inner = INNER[buf]
    signs = np.flatnonzero((buf[:-1] == 0xC2) & (buf[1:] < 0xC0))
    marks = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x80))
    inner[np.concatenate([signs, signs + 1, marks, marks + 1, marks + 2])] = False
    at = np.append(np.flatnonzero(inner), len(buf))
    first, last = at[np.searchsorted(at, starts)], at[np.searchsorted(at, ends) - 1] + 1
    some = first < ends
    return first[some], last[some], row[some]


def text_shingles(column: pa.Array, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, position in the row) of all shingles, rows in order."""
    buf, offsets = text_buffer(column)
    buf = lower_ascii_bytes(buf)
    starts, ends, row = words(buf, offsets)
    if bare:
        starts, ends, row = bare_words(buf, starts, ends, row)
    hashes, rows, at = shingles(hash_ranges(buf, starts, ends), row, SHINGLE, len(offsets) - 1)
    order = np.lexsort((at, rows))
    hashes, rows, at = hashes[order], rows[order], at[order]
    return hashes, rows, at - np.searchsorted(row, rows)


def scale_of(positions: int) -> int:
    return 1 << max(0, (positions - 1).bit_length())


class Index:
    """Distinct shingles of each template, and per scale the band table: coordinate -> least hash ->
    templates."""

    def __init__(self, templates: dict[str, str], bands: int, bare: bool = False):
        self.names, self.bare = list(templates), bare
        self.seeds = mix(np.arange(1, bands + 1, dtype=np.uint64)) | np.uint64(1)
        hashes, rows, _ = text_shingles(pa.array(list(templates.values())), bare)
        found = [hashes[rows == i] for i in range(len(self.names))]
        self.scales = [scale_of(len(x)) for x in found]
        self.sets = [np.unique(x) for x in found]
        self.all = np.unique(hashes)
        self.least = [(s[:, None] * self.seeds[None, :]).min(axis=0) for s in self.sets]

    def matches(self, hashes: np.ndarray, rows: np.ndarray, at: np.ndarray,
                percent: int) -> dict[tuple[int, int], list[int]]:
        """(row, template) -> template shingles held by each window that matches."""
        found: dict[tuple[int, int], list[int]] = {}
        hit = np.flatnonzero(np.isin(hashes, self.all))
        begin = np.searchsorted(rows, rows[hit])  # each hit's row starts here
        count = np.searchsorted(rows, rows[hit], side="right") - begin
        for scale in sorted(set(self.scales)):
            mine = [i for i, s in enumerate(self.scales) if s == scale]
            block = at[hit] // scale
            windows = {(int(b), int(n), int(k)) for b, n, own in zip(begin, count, block, strict=True)
                       for k in (own - 1, own) if k >= 0}
            for b, n, k in windows:
                inside = np.unique(hashes[b + k * scale:b + min((k + 2) * scale, n)])
                least = (inside[:, None] * self.seeds[None, :]).min(axis=0)
                here = {}
                for i in mine:
                    if (least == self.least[i]).any():  # a band agrees
                        held = int(np.isin(self.sets[i], inside).sum())
                        if 100 * held >= percent * len(self.sets[i]):
                            here[i] = held
                for i, held in here.items():
                    if not self.bare or all(self.told(i, j, inside) for j in here if j != i):
                        found.setdefault((int(rows[b]), i), []).append(held)
        return found

    def told(self, i: int, j: int, inside: np.ndarray) -> bool:
        """Whether a window holds half of what tells template i from j."""
        own = np.setdiff1d(self.sets[i], self.sets[j])
        return 2 * int(np.isin(own, inside).sum()) >= len(own)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] | None = None, percent: int = 80, bands: int = 96,
         bare: bool = False) -> DataFrame:
    """id, license, n_windows (matching windows), shared (most template shingles in one), and
    template_shingles. ``bare`` compares words without their outer punctuation."""
    known = TEMPLATES if templates is None else templates
    short = [name for name, text in known.items() if len(text.split()) < SHINGLE]
    if short:
        raise ValueError(f"templates need {SHINGLE} words: {short}")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        index = Index(known, bands, bare)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = sorted(index.matches(*text_shingles(batch["text"], bare), percent).items())
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"].take(pa.array([r for (r, _), _ in found], pa.int64())),
                    "license": pa.array([index.names[i] for (_, i), _ in found], pa.string()),
                    "n_windows": pa.array([len(x) for _, x in found], pa.int64()),
                    "shared": pa.array([max(x) for _, x in found], pa.int64()),
                    "template_shingles": pa.array([len(index.sets[i]) for (_, i), _ in found],
                                                  pa.int64())})

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, license string, n_windows bigint, shared bigint, "
                                "template_shingles bigint")


def oracle_sql(percent: int = 80) -> str:
    """The same result in DuckDB SQL, over all shingles of all texts."""
    rows = ", ".join("('" + name.replace("'", "''") + "', '" + text.replace("'", "''") + "')"
                     for name, text in TEMPLATES.items())
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"regexp_extract_all({low}, '[^\x20\x09-\x0D]+')"
    return rf"""
WITH t(license, notice) AS (VALUES {rows}),
tw AS (SELECT license, {split.format("notice")} AS w FROM t),
ts AS (SELECT license, len(w) - 4 AS m, w[p:p+4] AS s
       FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS p FROM tw)),
tn AS (SELECT license, CAST(2 ** ceil(log2(max(m))) AS BIGINT) AS b, count(DISTINCT s) AS n
       FROM ts GROUP BY license),
dw AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
ds AS (SELECT doc_id, p - 1 AS pos, w[p:p+4] AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM dw WHERE len(w) >= 5)),
h AS (SELECT DISTINCT doc_id, license, pos // b AS block, s
      FROM ds JOIN (SELECT DISTINCT license, s FROM ts) USING (s) JOIN tn USING (license)),
k AS (SELECT doc_id, license, unnest([block - 1, block]) AS k, s FROM h),
c AS (SELECT doc_id, license, k, count(DISTINCT s) AS held FROM k WHERE k >= 0 GROUP BY ALL)
SELECT doc_id, license, count(*) AS n_windows, max(held) AS shared, max(n) AS template_shingles
FROM c JOIN tn USING (license) WHERE 100 * held >= {percent} * n GROUP BY doc_id, license
"""
