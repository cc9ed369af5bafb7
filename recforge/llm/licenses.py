"""License scans by diagonal voting.

Every rolling hash of a few words of a document is joined to the places in the
license templates that have it.  A hit votes for its diagonal, the document's
place less the template's; votes are summed for each document, template and
diagonal.  Neighbouring diagonals are merged, since an inserted or missing word
moves the rest of a template by one, and the span they cover is verified word by
word in the document's text: its score is the share of the template's words that
stand there.

Licenses differ from each other in few words, so two more checks are made.  A
template's telling words (``licenses.Template.telling``) must all stand in the
span, and no telling word of another license may stand in it beside the
template's own words (a number may: versions are told apart by the first check).
Of spans that share half or more of the shorter one, the one that explains its
stretch best stays: its words found, less the words that stand between them
unexplained and the template's words not found.

A template of fewer than ``K`` words is sought by its own number of words.  A
short phrase (``BASE``) stands wherever a diagonal has all of its votes, which
is verified as well; it is never merged with neighbours.

Very long texts are split by their hashes, batch by batch, and verified by the
places that were hit; a text's own words are the largest thing held.
Ties between spans that explain equally much: the higher score, then the earlier
start, then the order of the templates.  Nulls: a null text is empty; a null id is an ordinary value.  Repeated rows each
get their row.  Empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import grams
from recforge.llm.decontam import same_row

K = 3  # words of a rolling hash
DRIFT = 3  # words by which neighbouring diagonals may differ
SIMILAR = 0.8  # share of a template's words that makes a span


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    base: bool = False
    telling: frozenset[str] = frozenset()

    @property
    def k(self) -> int:
        return min(K, len(self.words))


# Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices of widely used licenses: labels, words, and the telling ones of them.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2.0", "apache 2"),
    ("apache-2.0", "apache license version 2.0", "apache 2"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ""),
    ("apache-1.1", "licensed under the apache license version 1.1", "apache 1"),
    ("apache-1.1", "apache license version 1.1", "apache 1"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
             "public license as published by the free software foundation", "affero"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero 3"),
    ("agpl-3.0", "the gnu affero general public license version 3", "affero 3"),
    ("artistic-2.0", "licensed under the artistic license 2.0", "artistic 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ""),
    ("bsd-2-clause", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    ("bsd-3-clause", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission", "endorse"),
    ("bsl-1.0", "distributed under the boost software license version 1.0", "boost 1"),
    ("cc0-1.0", "cc0 1.0 universal public domain dedication", "cc0"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     "waived"),
    ("cc-by", "licensed under a creative commons attribution 4.0 international license", "attribution"),
    ("cc-by-nc", "licensed under cc by nc 4.0", "nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4.0 international license", "attribution noncommercial"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4.0", "nc nd"),
    ("cc-by-nc-nd", "licensed under a creative commons attribution noncommercial noderivatives 4.0 international license",
     "attribution noncommercial noderivatives"),
    ("cc-by-nc-nd", "licensed under a creative commons attribution noncommercial noderivs 3.0 unported license",
     "attribution noncommercial noderivs"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4.0", "nc sa"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4.0 international license",
     "attribution noncommercial sharealike"),
    ("cc-by-nd", "licensed under cc by nd 4.0", "nd"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4.0 international license", "attribution noderivatives"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivs 3.0 unported license", "attribution noderivs"),
    ("cc-by-sa", "licensed under cc by sa 4.0", "sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4.0 international license", "attribution sharealike"),
    ("epl-1.0", "made available under the terms of the eclipse public license v1.0", "eclipse v1"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2.0", "eclipse 2"),
    ("eupl-1.2", "licensed under the european union public licence version 1.2", "european 1 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation", "general"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general 2"),
    ("gpl-2.0", "the gnu general public license version 2", "general 2"),
    ("gpl-2.0", "gnu general public license v2", "general v2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general 3"),
    ("gpl-3.0", "the gnu general public license version 3", "general 3"),
    ("gpl-3.0", "gnu general public license v3", "general v3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies", ""),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation", "lesser"),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2.1", "lesser 2 1"),
    ("lgpl-2.1", "the gnu lesser general public license version 2.1", "lesser 2 1"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", "lesser 3"),
    ("lgpl-3.0", "the gnu lesser general public license version 3", "lesser 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction", ""),
    ("mpl-1.1", "subject to the mozilla public license version 1.1 you may not use this file except in compliance with the license",
     "mozilla 1"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0", "mozilla 2"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1.1", "sil"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", "do what the fuck you want to public license", "want"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for "
             "any damages arising from the use of this software", ""),
)
# Licenses known by one word, and how they are named.
NAMES = ("agpl", "bsd", "gpl", "isc", "lgpl", "mit", "zlib")
NAMED = ("released under the {} license", "under the terms of the {} license")


def template(label: str, phrase: str, telling: str = "", base: bool = False) -> Template:
    return Template(label, tuple(grams.words_of(phrase)), base, frozenset(telling.split()))


TEMPLATES = (*(template(label, p, base=True) for p, label in BASE.items()), *(template(*n) for n in NOTICES),
             *(template(name, p.format(name), name) for p in NAMED for name in NAMES))


def seeds(spark, templates: tuple[Template, ...]) -> DataFrame:
    """(gram, template, place): bounded by the templates' words."""
    rows = [(int(g), t, i) for t, x in enumerate(templates)
            for i, g in enumerate(grams.phrase_grams(list(x.words), x.k).view(np.int64))]
    return spark.createDataFrame(rows, "gram bigint, template int, place int")


def rolling(rows: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """(doc_id, h, places, hashes): all rolling hashes of the sizes, with the words' places."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("k", pa.int32()), ("grams", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            data, bounds = C.flat(batch.column(2))
            at = 0
            for part, ends in grams.chunks(data, bounds):
                words, n_words = grams.word_hashes(part, ends)
                ids = [batch.column(i).slice(at, len(n_words)) for i in (0, 1)]
                for k in sizes:
                    h, n = grams.gram_hashes(words, n_words, k)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                                     pa.array(h.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([*ids, pa.array([k] * len(n), pa.int32()), lists], schema=schema)
                at += len(n_words)

    return rows.mapInArrow(run, "doc_id bigint, h bigint, k int, grams array<bigint>")


def votes(rows: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(doc_id, h, diagonals): for each template and diagonal the template's places that were hit."""
    sizes = tuple(sorted({t.k for t in templates}))
    hits = rolling(rows, sizes).select("doc_id", "h", F.posexplode("grams").alias("pos", "gram")) \
        .join(F.broadcast(seeds(rows.sparkSession, templates)), "gram")
    # Sets, so that the votes of repeated rows are one vote.
    by_diagonal = hits.groupBy("doc_id", "h", "template", (F.col("pos") - F.col("place")).alias("diagonal")) \
        .agg(F.collect_set("place").alias("places"))
    return by_diagonal.groupBy("doc_id", "h") \
        .agg(F.collect_list(F.struct("template", "diagonal", "places")).alias("diagonals"))


def merged(diagonals: list[tuple[int, set[int]]], drift: int = DRIFT) -> list[list[tuple[int, set[int]]]]:
    """Diagonals in order, split wherever one is more than ``drift`` words past the one before."""
    groups: list[list[tuple[int, set[int]]]] = []
    for d, places in sorted(diagonals, key=lambda x: x[0]):
        if groups and d - groups[-1][-1][0] <= drift:
            groups[-1].append((d, places))
        else:
            groups.append([(d, places)])
    return groups


def best(rivals: list[tuple[int, float, int, int, int]]) -> list[tuple[int, float, int, int, int]]:
    """Of spans (explained, score, start, end, template) that share half or more of the shorter, the one that explains most."""
    stretches: list[list[tuple[int, float, int, int, int]]] = []
    reach = -1
    for x in sorted(rivals, key=lambda x: (x[2], x[3])):
        if x[2] >= reach:
            stretches.append([])
        stretches[-1].append(x)
        reach = max(reach, x[3])
    kept = []
    for stretch in stretches:
        taken: list[tuple[int, float, int, int, int]] = []
        for x in sorted(stretch, key=lambda x: (-x[0], -x[1], x[2], x[4])):
            if all(2 * (min(x[3], y[3]) - max(x[2], y[2])) < min(x[3] - x[2], y[3] - y[2]) for y in taken):
                taken.append(x)
        kept += taken
    return kept


def verify(words: list[str], diagonals: list[dict], templates: tuple[Template, ...], similar: float = SIMILAR):
    """Spans (label, base, start, end, score) that stand in a document's words."""
    others = frozenset(w for x in templates for w in x.telling if w.isalpha())
    by_template: dict[int, list[tuple[int, set[int]]]] = {}
    for x in diagonals:
        by_template.setdefault(x["template"], []).append((x["diagonal"], set(x["places"])))
    spans, rivals = [], []
    for t, found in by_template.items():
        template = templates[t]
        need, n = len(template.words) - template.k + 1, len(template.words)
        if template.base:
            spans += [(template.label, True, d, d + n, 1.0) for d, places in found
                      if len(places) == need and tuple(words[d:d + n]) == template.words]
            continue
        for group in merged(found):
            if template.k * sum(len(p) for _, p in group) < similar * n:  # a place covers k words at most
                continue
            pairs = {(d + p + i, p + i) for d, places in group for p in places for i in range(template.k)}
            pairs = {(at, p) for at, p in pairs if words[at] == template.words[p]}
            at, stands = {a for a, _ in pairs}, {p for _, p in pairs}
            if len(stands) < similar * n or any(w in template.telling and p not in stands for p, w in enumerate(template.words)):
                continue
            start, end = min(at), max(at) + 1
            if not {words[i] for i in range(start, end) if i not in at}.isdisjoint(others - set(template.words)):
                continue
            explained = len(at) - (end - start - len(at)) - (n - len(stands))
            rivals.append((explained, len(stands) / n, start, end, t))
    spans += [(templates[t].label, False, start, end, score) for _, score, start, end, t in best(rivals)]
    return sorted(spans, key=lambda s: (s[2], s[3], s[0]))


SCAN_DDL = "doc_id bigint, n_words bigint, spans array<struct<label:string,base:boolean,start:bigint,end:bigint,score:double>>"


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, n_words, spans) for each row; places are words from 0, ends exclusive."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([
        ("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])
    rows = C.texts(docs).select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = votes(rows, templates)
    both = rows.join(found, same_row(rows, found), "left").select(rows["doc_id"], "text", "diagonals")

    def run(batches):
        names = ("label", "base", "start", "end", "score")
        for batch in batches:
            data, bounds = C.flat(batch.column(1))
            n_words = [grams.word_hashes(*c)[1] for c in grams.chunks(data, bounds)]
            spans = [[] if d is None else [dict(zip(names, s)) for s in verify(grams.words_of(t.as_py()), d, templates, similar)]
                     for t, d in zip(batch.column(1), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n_words)),
                                              pa.array(spans, schema.field(2).type)], schema=schema)

    return both.mapInArrow(run, SCAN_DDL)
