"""Licence notices in the forms of the data and of real files."""

from __future__ import annotations

import pytest

from medialoom.llm import licenses

LINES = {
    "All rights reserved.": "Proprietary",
    "Copyright (c) 2024 Acme Inc. All rights reserved.": "Proprietary",
    "Copyright 2024 Acme GmbH, all rights reserved": "Proprietary",
    "Copyright (c) 2024 Jane Doe. Licensed under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0. All rights reserved.": "Apache-2.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


def test_each_line_form_is_found(spark):
    prose = [f"w{k} of the text and more w{k + 1}" for k in range(40)]
    rows = [(i, f"a{i}/x.txt", "\n".join([*prose, x, *prose])) for i, x in enumerate(LINES)]
    d = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: r.license for r in licenses.scan(d).collect()}
    assert got == dict(enumerate(LINES.values()))


@pytest.mark.parametrize("lines", [10, 10_000, 10_000_000])
def test_reserved_line_in_corpora_of_any_size(lines):
    s = licenses.Scorer({b"all": lines // 50, b"rights": lines // 1000 + 1, b"reserved": lines // 1000 + 1, b"the": lines // 2}, lines)
    assert s.best(licenses.terms(b"All rights reserved."))[1] == "Proprietary"
    assert s.best(licenses.terms(b"Copyright. All rights reserved."))[0] > 0.99


APACHE_HEADER = """# Copyright 2024 Jane Doe
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
import os
import sys"""
GPL_HEADER = """Copyright (C) 2024 Jane Doe
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
int main() { return zeta(quux, corge, grault); }"""


def filled(name):
    return licenses.TEXTS[name].replace("Copyright (c)", "Copyright (c) 2024 Jane Doe and contributors", 1)


def test_complete_texts_and_wrapped_headers(spark):
    prose = "\n".join(f"w{k} of the text and more w{k + 1}" for k in range(40))
    rows = [(filled(n), n, True) for n in licenses.TEXTS]
    rows += [(f"{prose}\n\n{filled('MIT')}\n\n{prose}", "MIT", False), (APACHE_HEADER, "Apache-2.0", False), (GPL_HEADER, "GPL-3.0", False)]
    rows += [(GPL_HEADER.replace("GNU General", "GNU Affero General"), "AGPL-3.0", False), (f"{prose}\nit is Licensed\nunder. Released under the\nMIT License. {prose}", "MIT", False), (prose, None, False)]
    d = spark.createDataFrame([(i, f"a{i}/LICENSE", t) for i, (t, _, _) in enumerate(rows)] + [(100 + i, f"a{i}/x.txt", "nothing") for i in range(len(rows))], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in licenses.scan(d).collect()}
    assert [got[i].license for i in range(len(rows))] == [n for _, n, _ in rows]
    assert [got[i].effective_license for i in range(100, 100 + len(rows))] == [n for _, n, _ in rows]
    assert [i for i, (_, _, w) in enumerate(rows) if w and not got[i].whole_file] == []


def test_quick_bound_is_lossless():
    import random

    r, s = random.Random(4), licenses.Scorer({b"the": 900, b"license": 3}, 1000)
    words = [t.decode() for t in licenses.TERMS[::20]] + ["zzz", "qqq", "the", "license"]
    for _ in range(3000):
        tokens = [x.encode() for x in r.choices(words, k=r.randint(1, 15))]
        assert s.best(licenses.Counter(tokens))[0] < licenses.THRESHOLD or (s.can(*s.mass(tokens)) and not s.telling.isdisjoint(tokens))
        cut = r.randint(0, len(tokens))
        (a, b), (c, d) = s.mass(tokens[:cut]), s.mass(tokens[cut:])
        assert s.can(a + c, b + d) or not s.can(*s.mass(tokens))
