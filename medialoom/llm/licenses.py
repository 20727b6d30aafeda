"""License detection by TF-IDF cosine and inheritance down the directory tree.

A passage of a file is a sparse TF-IDF vector; one whose cosine to a template reaches
``THRESHOLD`` declares that template's license.  Templates are one-line notices, standard
headers and, in ``license_texts``, complete licenses.  Passages are the whole file (a
licence file), each line, each block (a run of lines with terms) and each sentence of a
line or a block; where none of these declares anything, every run of up to
``RUN_LINES`` lines of a block.  A whole file that is a license declares that one alone.

Document frequencies of the template terms cover all lines of the corpus; a template
term that no line has weighs as much as the rarest that some line has, any other term as
one that no line has, which is most.
``RESERVED``, which stands beside many licenses, only counts where nothing else does.

A file that declares nothing takes the license of the licence file in its nearest
ancestor directory: distinct directories are joined with their ancestors' licence
files, so a directory that holds a third of all files is one row until the last join.

Defined cases: null text declares nothing; a null path is in no directory; of several
licence files in one directory the one with the highest score, then the smallest
license name, counts; ties among templates go to the smallest name; repeated rows are
reported each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from medialoom.llm.common import batch_of, materialise, table, texts_of

THRESHOLD = 0.8
#: Notices by which works declare these licenses.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
}
_GNU = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} License as published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version."
_GNU_NO_WARRANTY = " This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2} License for more details. You should have received a copy of the GNU {2} License along with this {0}. If not, see <https://www.gnu.org/licenses/>."
_CC = "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons {0} 4.0 International Public License (\"Public License\")."


def _gnu(*fields: str) -> list[str]:
    return [x.format(*fields) for x in (_GNU, _GNU + _GNU_NO_WARRANTY)]


def _cc(name: str) -> list[str]:
    return [f"Creative Commons {name} 4.0 International Public License", f"Licensed under the Creative Commons {name} 4.0 International License.", _CC.format(name)]


#: Standard headers and the openings of licenses whose text is not at hand.  Relatives of
#: the licenses above are here so that their files are not taken for those.
HEADERS = {
    "AGPL-3.0": _gnu("program", ":", "Affero General Public", "3"),
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "CC-BY-4.0": _cc("Attribution"),
    "CC-BY-NC-4.0": _cc("Attribution-NonCommercial"),
    "CC-BY-SA-4.0": _cc("Attribution-ShareAlike"),
    "CC-BY-ND-4.0": _cc("Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _cc("Attribution-NonCommercial-NoDerivatives"),
    "GPL-2.0": _gnu("program", ";", "General Public", "2"),
    "GPL-3.0": _gnu("program", ":", "General Public", "3"),
    "LGPL-2.1": _gnu("library", ";", "Lesser General Public", "2.1"),
    "LGPL-3.0": _gnu("library", ":", "Lesser General Public", "3") + _gnu("program", ":", "Lesser General Public", "3"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
}
TEXTS = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
ALL = {n: [*TEMPLATES.get(n, []), *HEADERS.get(n, []), *([TEXTS[n]] if n in TEXTS else [])] for n in sorted({*TEMPLATES, *HEADERS, *TEXTS})}
#: Longest run of lines that is looked for inside a block; longer than any header.
RUN_LINES = 24
RESERVED = "Proprietary"
#: A sentence ends before these; "all rights reserved" is one wherever it starts.
_SENTENCE = re.compile(rb"(?<=[.;:!?])\s+|[\s,]+(?=all\s+rights\s+reserved)", re.IGNORECASE)
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+(?:\.[0-9]+)?")
TERMS = sorted({t for v in ALL.values() for x in v for t in _TERM.findall(x.lower().encode())})


def terms(line: bytes) -> Counter:
    return Counter(_TERM.findall(line.lower()))


def frequencies(files: DataFrame) -> tuple[dict[bytes, int], int]:
    """In how many lines of the corpus each template term stands; the number of lines."""
    schema = T.StructType.fromDDL("term binary, n long")
    known = frozenset(TERMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for t in texts_of(b, "text"):
                lines = t.split(b"\n")
                n[b""] += len(lines)
                for x in lines:
                    n.update(known.intersection(_TERM.findall(x.lower())))
        yield batch_of(schema, term=list(n), n=list(n.values()))

    got = files.select("text").mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = {bytes(r.term): r.n for r in got}
    return df, df.pop(b"", 0)


class Scorer:
    def __init__(self, df: dict[bytes, int], lines: int):
        rarest = min((n for t, n in df.items() if n), default=0)
        self.idf = {t: math.log((1 + lines) / (1 + df.get(t, rarest))) + 1 for t in TERMS}
        self.rest = math.log(1 + lines) + 1
        self.names = [name for name in sorted(ALL) for _ in ALL[name]]
        self.weights: dict[bytes, list[tuple[int, float]]] = {}
        for k, x in enumerate(x for name in sorted(ALL) for x in ALL[name]):
            for t, w in self.unit(terms(x.encode())).items():
                self.weights.setdefault(t, []).append((k, w))
        # the most common terms that no template is reached with alone: passages of nothing else are passed over
        common, left = set(), [THRESHOLD**2 - 1e-6] * len(self.names)
        for t in sorted(TERMS, key=self.idf.__getitem__):
            for k, w in self.weights[t]:
                left[k] -= w * w
            if min(left) < 0:
                break
            common.add(t)
        self.telling = frozenset(TERMS) - common

    def unit(self, tf: Counter) -> dict[bytes, float]:
        v = {t: n * self.idf.get(t, self.rest) for t, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    def best(self, tf: Counter) -> tuple[float, str | None]:
        c, top, name = [0.0] * len(self.names), 0.0, None
        for t, x in self.unit(tf).items():
            for k, w in self.weights.get(t, ()):
                c[k] += x * w
        for n, x in zip(self.names, c, strict=True):
            if x > top + 1e-12:
                top, name = x, n
        return top, name

    def mass(self, tokens: list[bytes]) -> tuple[float, float]:
        """The norm of the part on template terms and the square of the rest's norm."""
        inside = outside = 0.0
        for t, n in Counter(tokens).items():
            w = self.idf.get(t)
            if w is None:
                outside += (n * self.rest) ** 2
            else:
                inside += (n * w) ** 2
        return math.sqrt(inside), outside

    def can(self, inside: float, outside: float) -> bool:
        """False only if a passage does not reach the threshold, given the sums of ``mass`` over its parts."""
        return inside > 0 and (1 - THRESHOLD**2) * inside * inside * (1 + 1e-9) >= THRESHOLD**2 * outside

    def declares(self, tf: Counter) -> tuple[float, str] | None:
        if self.bound(tf) >= THRESHOLD:
            c, name = self.best(tf)
            if c >= THRESHOLD:
                return c, name
        return None

    def bound(self, tf: Counter) -> float:
        """An upper bound of the cosine to any template: the norm of the part on template terms."""
        inside = sum((n * self.idf[t]) ** 2 for t, n in tf.items() if t in self.idf)
        outside = sum((n * self.rest) ** 2 for t, n in tf.items() if t not in self.idf)
        return math.sqrt(inside / (inside + outside)) if inside else 0.0


def blocks_of(lines: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Maximal runs of lines that have terms, as [start, end)."""
    start = None
    for k, x in enumerate([*lines, []]):
        if x and start is None:
            start = k
        elif not x and start is not None:
            yield start, k
            start = None


def judged(s: Scorer, text: bytes) -> tuple[str | None, float | None, bool]:
    """license, score, and whether it is that of the whole file."""
    raw = text.split(b"\n")
    lines = [_TERM.findall(x.lower()) for x in raw]
    telling = [not s.telling.isdisjoint(x) for x in lines]
    if not any(telling):
        return None, None, False
    mass = [s.mass(x) for x in lines]
    both = lambda a, z: (sum(i for i, _ in mass[a:z]), sum(o for _, o in mass[a:z]))
    whole = s.declares(Counter(t for x in lines for t in x)) if s.can(*both(0, len(lines))) else None
    if whole and whole[1] != RESERVED:
        return whole[1], whole[0], True
    found: set[tuple[bool, float, str]] = set()

    def look(tf: Counter) -> None:
        if hit := s.declares(tf):
            found.add((hit[1] == RESERVED, -hit[0], hit[1]))

    blocks = [(a, z) for a, z in blocks_of(lines) if any(telling[a:z])]
    for a, z in blocks:
        sentences = [x for x in _SENTENCE.split(b"\n".join(raw[a:z])) if b"\n" in x]
        for k in range(a, z):
            if telling[k]:
                if s.can(*mass[k]):
                    look(Counter(lines[k]))
                parts = _SENTENCE.split(raw[k])
                sentences += parts if len(parts) > 1 else []
        if z - a > 1 and s.can(*both(a, z)):
            look(Counter(t for x in lines[a:z] for t in x))
        for x in sentences:
            tokens = _TERM.findall(x.lower())
            if not s.telling.isdisjoint(tokens) and s.can(*s.mass(tokens)):
                look(Counter(tokens))
    if all(reserved for reserved, *_ in found):
        for a, z in blocks:
            for k in range(a, z):
                inside, outside, tf, at, tells = *mass[k], Counter(lines[k]), k + 1, telling[k]
                for n in range(k + 1, min(z, k + RUN_LINES)):
                    inside, outside, tells = inside + mass[n][0], outside + mass[n][1], tells or telling[n]
                    if tells and s.can(inside, outside):
                        for x in lines[at : n + 1]:
                            tf.update(x)
                        at = n + 1
                        look(tf)
    if not found:
        return None, None, False
    _, c, name = min(found)
    return name, -c, whole is not None


def declared(files: DataFrame) -> DataFrame:
    """doc_id, path, license, score, whole_file: license is null where nothing is declared."""
    df, lines = frequencies(files)
    sent = files.sparkSession.sparkContext.broadcast(Scorer(df, lines))
    schema = T.StructType.fromDDL("doc_id long, path string, license string, score double, whole_file boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for b in batches:
            rows = [judged(s, t) for t in texts_of(b, "text")]
            a, c, w = map(list, zip(*rows, strict=True)) if rows else ([], [], [])
            yield batch_of(schema, doc_id=b.column(0), path=b.column(1), license=a, score=c, whole_file=w)

    return files.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string")).mapInArrow(run, schema)


def inherited(files: DataFrame) -> DataFrame:
    """Adds directory, effective_license and inherited_from to rows of ``declared``."""
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(r"(?i)^(licen[cs]e|copying|unlicense)(\.\w+)?$")
    f = files.withColumn("directory", F.regexp_replace("path", r"/?[^/]*$", ""))
    notices = f.where(named & F.col("license").isNotNull())
    order = W.partitionBy("directory").orderBy(F.desc("score"), "license")
    at = notices.groupBy("directory", "license").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(order)).where("n = 1").select(F.col("directory").alias("ancestor"), F.col("license").alias("from_license"))
    dirs = f.where("license IS NULL AND directory IS NOT NULL").select("directory").distinct()
    parts = F.split("directory", "/")
    up = dirs.select("directory", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.when(k == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, k), "/")))).alias("ancestor")).distinct()
    nearest = up.join(at, "ancestor").groupBy("directory").agg(F.max_by(F.struct("ancestor", "from_license"), F.length("ancestor")).alias("near"))
    out = f.join(nearest, "directory", "left")
    own = F.col("license").isNotNull()
    return out.select(
        "doc_id", "path", "directory", "license", "score", "whole_file",
        F.coalesce("license", "near.from_license").alias("effective_license"),
        F.when(~own, F.col("near.ancestor")).alias("inherited_from"),
    )


def scan(files: DataFrame) -> DataFrame:
    found, _ = materialise(declared(files), "licenses")
    return inherited(found)


def paths_of(docs: DataFrame) -> DataFrame:
    """Documents as files, ten to a directory: every tenth is its directory's LICENSE, every thousandth its block's."""
    block = F.concat(F.lit("b"), F.floor(F.col("doc_id") / 1000))
    leaf = F.concat(block, F.lit("/d"), F.floor(F.col("doc_id") / 10))
    path = F.when(F.col("doc_id") % 1000 == 0, F.concat(block, F.lit("/LICENSE"))).when(F.col("doc_id") % 10 == 0, F.concat(leaf, F.lit("/LICENSE"))).otherwise(F.concat(leaf, F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text")


def op3(spark, sf_dir) -> DataFrame:
    return scan(paths_of(table(spark, sf_dir, "documents")))
